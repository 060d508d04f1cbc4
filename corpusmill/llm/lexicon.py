"""General words of abusive, hateful and sexual language in English, German, French and Spanish.

A parameter of the scorer, not a closed list; words and phrases of a corpus of its own are learned from its labels.
"""

from __future__ import annotations


def _w(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: Terms of abuse that are hardly used otherwise.
INSULT = _w("""
idiot idiots moron morons imbecile imbeciles cretin cretins halfwit bastards whore slut asshole arsehole scumbag dirtbag
lowlife dickhead motherfucker fucker shithead shit wanker twat cunt jackass dumbass scum
dreckskerl arschloch abschaum hurensohn hure schlampe drecksack trottel wichser mistkerl missgeburt drecksau vollidiot vollpfosten
crétin salaud salope connard connasse pute enculé ordure abruti fumier imbécile
cabrón cabron canalla idiota imbécil puta gilipollas hijoputa malnacido zorra bastardo escoria mierda
""")
#: Abuse only when aimed at someone.
AIMED = _w("bastard bitch pig swine parasite dog dogs fool coward liar rat schwein sau hund porc chien cerdo perro basura rata cochon")
SCORN = _w("""
ugly worthless stupid filthy pathetic brainless lying rotten disgusting fucking useless stinking
dumm dummer dreckig dreckiger widerlich widerlicher verlogen verlogener erlogener erbärmlich mieser stinkend maul 
minable répugnant répugnante pourri stupide gueule inútil asqueroso podrido miserable sucio boca
""")
SEXUAL = _w("""
pussy nipples breasts tits moaned moaning horny busty fuck fucked cum orgasm blowjob dripping panting topless thighs
brüste stöhnte eindrang ficken seins gémissait pénétrait caressait baiser pechos gemía penetraba follar tetas
""")
INTIMATE = _w("""
cock dick naked nude bare licked spread wet lips tongue touched undress ass 
nackt nackten küsste nue nus desnuda desnudo desnudos besaba 
""")
VIOLENCE = _w("""
rip bleed choke drown kill strangle knife beat slap stab burn shoot hang drag throat 
schlage tot töte umbringen verreck tuer crever matar 
""")
DEHUMANISING = _w("""
vermin rats lice maggots plague disease poison filth subhuman cockroaches pigs animals
ungeziefer ratten vermine alimañas ratas plaga 
""")
#: Groups that count wherever they meet words of harm.
GROUPS = _w("""
foreigners migrants immigrants refugees women 
ausländer étrangers extranjeros inmigrantes
""")
SECOND_PERSON = _w("you your yours yourself du dich dir dein deine deinen deiner tu te ton ta tes toi eres tus ti")
# Parts of statements about a group and of threats, wherever the group or the object is not known by name (see Reader.aimed).
#: People by origin, faith, sex and the like; they count as subject of such a statement only.
PEOPLE = _w("""
muslims jews christians hindus sikhs catholics protestants gypsies roma blacks whites arabs asians africans mexicans turks kurds poles russians ukrainians chinese indians pakistanis
gays lesbians homosexuals queers transsexuals cripples disabled beggars homeless asylum seekers natives aborigines girls females men people folk they them these those
muslime juden christen zigeuner türken kurden araber schwarze schwarzen polen russen flüchtlinge asylanten migranten frauen weiber schwule schwulen lesben behinderte behinderten leute diese sie
musulmans juifs chrétiens tziganes gitans roms arabes noirs africains turcs réfugiés migrants immigrés femmes pédés homosexuels handicapés gens ils elles ceux
musulmanes judíos cristianos gitanos moros negros árabes africanos turcos refugiados migrantes mujeres maricones homosexuales discapacitados gente ellos ellas esos estos
""")
PESTS = _w("""
vermin rats lice maggots apes monkeys subhuman subhumans cockroaches parasites leeches locusts scum swine pigs ungeziefer ratten läuse maden affen untermenschen kakerlaken parasiten abschaum schweine
vermine rats poux singes cafards parasites racaille porcs alimañas ratas piojos monos cucarachas parásitos escoria cerdos
""")
#: As above if the subject is known to be people; common elsewhere.
BLIGHT = _w("plague disease poison filth rot cancer animals beasts pest seuche krankheit gift dreck krebs tiere peste maladie poison ordure cancer bêtes animaux plaga enfermedad veneno basura cáncer animales bestias")
#: Animals and things that may soberly be called vermin or be put down.
BEASTS = _w("""
foxes rabbits mice pigeons moles squirrels crows dogs cats wolves birds insects deer badgers rodents cattle sheep cows horses hens bees wasps ants moths weasels animals beasts pests goods documents
füchse kaninchen mäuse tauben maulwürfe krähen hunde katzen wölfe vögel insekten rehe dachse rinder schafe kühe pferde tiere nager renards lapins souris pigeons corbeaux chiens chats loups oiseaux insectes bovins animaux
zorros conejos ratones palomas cuervos perros gatos lobos pájaros insectos ganado animales
""")
ARE = _w("are were is sind waren sont étaient son eran")
FILLER = _w("""
closer nearer lower beneath to näher nothing but all only just like no better than worse a an the such simply really these those filthy dirty mere pure human nur alle wie bloß nichts als eine ein die der das schlimmer que des de la le une un comme rien tous toutes pires
todos todas solo sólo como unas unos una más peor peores nada
""")
NOTHING = _w("nothing nichts rien nada")
#: Words before a verb that name nobody.
NOBODY = _w("there here what which where that this dort hier dies dieses diese voici voilà donde estas")
FINISH, JOB = _w("finish"), _w("job")
NOT = _w("not never no hardly barely aren't isn't nothing keine kein nicht nichts rien nada pas jamais no nunca")
HUMAN = _w("human humans menschen humains personas humanos")
BREED = _w("breed multiply spawn vermehren reproduisent multiplient reproducen multiplican")
LIKE = _w("like wie comme como")
BELONG = _w("belong belongs deserve deserves gehören gehört verdienen méritent merecen")
PLACES = _w("""
sea ground cage cages gutter camp camps oven ovens gallows sewer fire grave river zoo gas rope noose pit meer lager käfig käfige galgen gosse gas ofen grab fluss zoo mer cage cages camp camps égout fosse potence four rivière
mar jaula jaulas campo horca fosa alcantarilla horno río
""")
OUGHT = _w("should must ought müssen sollen sollten muss gehören doivent devraient faut deben deberían hay")
HARMED = _w("""
shot hanged hung burned burnt gassed exterminated killed drowned eradicated slaughtered lynched castrated sterilised butchered whipped erschossen gehängt verbrannt vergast ausgerottet getötet ertränkt umgebracht geschlachtet
fusillés pendus brûlés gazés exterminés tués noyés brûler tuer noyer exterminer pendre gazer fusilar quemar matar ahogar exterminar ahorcar fusilados quemados ahorcados exterminados
""")
HARM = _w("kill burn hang shoot drown gas exterminate slaughter lynch butcher tötet verbrennt hängt erschießt vergast tuez brûlez pendez noyez maten quemen ahorquen")
ALL = _w("all every the those these alle die diese tous les ces todos los esos")
KNOW = _w("know knows weiß wissen sais sait savons sé sabemos sabe")
WHERE = _w("where which when wo wann welche welchen welcher où quand quel quelle dónde donde cuándo qué")
HOPE = _w("hope wish pray hoffe hoffentlich espère espero ojalá")
ILL = _w("die rot burn choke suffer drown bleed cancer hang dead perish stirbst verreckst brennst verrotte crèves crève brûle pourrisses mueras muera pudras ardas")
FUNERAL = _w("coffin ambulance stretcher undertaker hearse sarg krankenwagen cercueil ambulance ataúd ambulancia")
NEED = _w("need needs brauchen brauchst besoin necesitar necesitarás")
